"""Short forms for dates and results in tests."""

from datetime import date, datetime


def day(text):
    return date.fromisoformat(text)


def moment(text):
    return datetime.fromisoformat(text)


def rows(df, *columns):
    """Sorted tuples of the chosen columns."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def one(df):
    found = df.collect()
    assert len(found) == 1
    return found[0].asDict()

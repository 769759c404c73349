"""Writers: marts, dated snapshots, exports and score tables."""

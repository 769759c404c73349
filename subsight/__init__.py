"""Subscription-product analytics as Spark DataFrame operators."""

"""Betting-ledger session analytics as Spark DataFrame operators."""

"""Reading, conforming and writing the ledger tables."""

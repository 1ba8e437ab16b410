"""Relational, statistical, contract, ledger and document operators."""

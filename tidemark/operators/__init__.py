"""DataFrame operators over market data."""

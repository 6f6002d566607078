"""The registered queries: inputs rendered from the test tables, the library's
operators over them, and their SQL oracles."""

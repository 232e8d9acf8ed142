"""Sources and sinks: parquet (A1, A3, A5, A7, A10, A11, A13, A14, versioned
dimension tables) and jdbc (A2, A4)."""

"""The library's operators run over the driver's tables, each with its SQL oracle."""

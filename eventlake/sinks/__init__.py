"""Tables and messages to write."""

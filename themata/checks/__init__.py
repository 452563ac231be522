"""The registered queries and, for each that SQL can express, the same result in ANSI SQL."""

"""The jobs over the supplied trial tables, and equivalent SQL to check them against."""

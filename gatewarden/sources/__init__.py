"""Tables in, results out."""

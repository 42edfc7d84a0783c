"""Tables and parsers."""

"""Reading untyped sources and keeping their versions."""

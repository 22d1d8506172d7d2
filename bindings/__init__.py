"""The library bound to the driver's tables."""

"""The keyed merge fed by a file stream."""

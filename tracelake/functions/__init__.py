"""Part of tracelake."""

"""Part of chatloom."""

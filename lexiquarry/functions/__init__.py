"""Part of lexiquarry; see README.md."""

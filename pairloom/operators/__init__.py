"""Part of pairloom."""

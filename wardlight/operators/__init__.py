"""Set-based operators over the clinical tables."""

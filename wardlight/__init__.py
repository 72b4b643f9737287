"""Hospital care-outreach analytics as Spark DataFrame plans."""

from wardlight.sources.clinical import ClinicalTables, read_clinical

__all__ = ["ClinicalTables", "read_clinical"]

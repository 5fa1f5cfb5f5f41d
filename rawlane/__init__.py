"""rawlane: file intake, data-quality routing and billing analytics as Spark DataFrame jobs."""

from rawlane.specs import BASE_OFICIAL, DEFAULT_SPECS, FATURAMENTO, USUARIOS, DatasetSpec

__all__ = ["BASE_OFICIAL", "DEFAULT_SPECS", "FATURAMENTO", "USUARIOS", "DatasetSpec"]

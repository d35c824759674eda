from staffline.sources.tables import BASE_TABLES, Catalog, catalog

__all__ = ["BASE_TABLES", "Catalog", "catalog"]

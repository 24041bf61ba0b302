"""SQL texts, whole jobs and the catalogue of registered queries."""

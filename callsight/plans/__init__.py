"""MLlib pipelines, scoring and recommendation plans."""

"""Jobs: one table into bronze, one table into silver, a whole source, a registry, watermarks."""

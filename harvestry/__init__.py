"""Spark operators for scraped-data lakehouses: extract, clean, enrich, batch, measure."""

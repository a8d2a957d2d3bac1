"""Import, clean, summarize, audit and anonymize large administrative microdata on Spark."""

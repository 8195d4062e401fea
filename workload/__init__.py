"""The driver's tables mapped onto the landing tables, and one query per operator."""

"""End-to-end plans: the three customer tables and the query registry."""

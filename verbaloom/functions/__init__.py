"""Column expressions; nothing here plans a job."""

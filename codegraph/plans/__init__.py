"""Whole extraction plans: SQL scripts, models, migrations, embedded SQL, chunks."""

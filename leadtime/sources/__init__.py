"""Reading and writing: raw files, stored tables, reports, run logs, requests."""

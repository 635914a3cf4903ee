"""The silver, gold and reporting tables, and the jobs that write them."""

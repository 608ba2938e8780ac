"""PySpark jobs for cashback-offer data: pages to offers, history, matching and reports."""

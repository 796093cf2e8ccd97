"""Training-data operators over document tables (nothing else imports this package)."""

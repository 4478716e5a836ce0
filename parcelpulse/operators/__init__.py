"""DataFrame-to-DataFrame operators; nothing here starts a job."""

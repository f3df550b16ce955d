"""DataFrame operators. None of them runs a job or changes a session setting."""

"""Incremental loading. The reports themselves are batch jobs and have no streaming form."""

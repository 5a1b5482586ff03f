"""DataFrame operators: every function takes and returns ``DataFrame``."""

"""DataFrame operators: pure functions ``DataFrame(s), params -> DataFrame``."""

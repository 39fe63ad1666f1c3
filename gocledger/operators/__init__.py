"""Domain operators: each is ``DataFrame(s) -> DataFrame``."""

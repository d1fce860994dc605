"""DataFrame -> DataFrame operators; each is usable with ``DataFrame.transform``."""

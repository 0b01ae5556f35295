"""DataFrame -> DataFrame operators of every layer."""

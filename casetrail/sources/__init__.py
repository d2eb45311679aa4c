"""Raw sources (explicit-schema readers, test-data derivation) and table sinks."""

"""Sources and sinks: driver tables, raw record files, split tables, JSON sidecars."""

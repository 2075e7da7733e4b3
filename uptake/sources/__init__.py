"""Sources and sinks: raw CSV readers, typed loaders, writers, test binding."""

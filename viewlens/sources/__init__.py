"""Sources and sinks: file readers, result-table loaders/writers, adapters."""

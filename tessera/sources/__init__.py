"""Sources and sinks: delimited text readers/writers, stand-in views, generators."""

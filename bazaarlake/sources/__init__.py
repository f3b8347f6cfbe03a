"""Sources and sinks: tables of the lake, the landing zone and the sample tables."""

"""Sources and sinks (S-*) plus the derived fixture views."""

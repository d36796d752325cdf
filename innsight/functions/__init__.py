"""Pure ``Column`` functions: no UDF, no action, all inside Catalyst."""

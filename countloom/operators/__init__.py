"""DataFrame operators: tables in, tables out, nothing collected."""

"""DataFrame operators: decode, filter, project, flatten, infer and reports."""

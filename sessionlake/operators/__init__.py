"""DataFrame operators: conforming, nesting, change data, clustering."""

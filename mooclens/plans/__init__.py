"""Report catalogue, dependency-ordered builds and user-supplied queries."""

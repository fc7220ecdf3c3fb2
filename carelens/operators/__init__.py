"""DataFrame → DataFrame operators, grouped as in README.md."""

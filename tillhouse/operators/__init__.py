"""Relational building blocks: DataFrame in, DataFrame out, no actions."""

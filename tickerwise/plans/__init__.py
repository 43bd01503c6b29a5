"""Named queries over the input tables and their DuckDB SQL twins."""

"""Journal sources, tables at rest and report files."""

"""kstate: a PySpark engine from heterogeneous source material to a versioned knowledge state."""

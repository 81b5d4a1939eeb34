"""Named workloads, the queries registered from them, and their SQL twins."""

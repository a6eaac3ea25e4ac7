"""Query plans: the registered queries, their SQL twins, the pipeline and plan checks."""

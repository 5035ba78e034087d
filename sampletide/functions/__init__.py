"""Column-returning helpers. No Python UDF: every one compiles into whole-stage code."""

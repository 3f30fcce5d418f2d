"""Column expressions; none needs Python on the executors, all keep to whole-stage code generation where Spark does."""

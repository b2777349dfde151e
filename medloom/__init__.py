"""medloom: clinical source data to OMOP CDM tables, written as Spark DataFrame operators."""

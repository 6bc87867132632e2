"""Credit-risk data mart, scoring and drift monitoring as Spark DataFrame operators."""

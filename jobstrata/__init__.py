"""Labour-market analytics over job postings, written as Spark DataFrame operators."""

"""News intelligence on Spark: dated, sourced text items in, ranked daily editions out."""

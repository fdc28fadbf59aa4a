"""Session settings that suit these jobs."""

SETTINGS = {
    # Sizes are chosen at run time: small shuffle partitions are merged, skewed joins split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A wide vector or a long text is kilobytes per row; smaller batches reach Python sooner.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}

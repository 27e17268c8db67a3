"""DataFrame -> DataFrame operators: attribution, metrics, features, anomalies,
drill-down, freshness, normalisation and the forecast."""

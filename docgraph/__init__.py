"""docgraph: DataFrame operators for large collections of dated, regional documents."""

"""corpgraph: data integration and entity resolution as Spark plans."""

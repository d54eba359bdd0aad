"""corpusloom: a Spark-native engine for corpora of archived press documents."""

"""Tessera: a Spark-native engine that turns corpora and interaction records into analysed networks."""

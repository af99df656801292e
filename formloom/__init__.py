"""formloom: Spark-native extraction, normalisation and evaluation of clinical form data."""

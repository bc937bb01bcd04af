"""Patient and encounter analytics as Spark DataFrame jobs: landing, bronze, silver, gold."""

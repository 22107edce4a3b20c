"""docloom: document analytics, governance queries and text preparation as Spark DataFrame programs."""

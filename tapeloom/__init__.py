"""Trade-tick analytics on PySpark: bars, order flow, labels, scoring, replay."""

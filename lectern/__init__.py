"""lectern: document annotation and corpus analytics on PySpark DataFrames."""

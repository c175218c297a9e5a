"""cohortica: segmentation analytics and corpus preparation on PySpark."""

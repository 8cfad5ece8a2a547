"""ebbflow: population mobility and epidemiology tables on PySpark."""

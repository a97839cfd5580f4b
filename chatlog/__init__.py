"""chatlog: a PySpark-native engine for analysing language-model traffic.

Every operator takes and returns DataFrames (or Columns); Spark plans, partitions and
runs the work. Operators are lazy, but for the few that pass over their input several
times: those write a narrow intermediate table when they are called.
"""

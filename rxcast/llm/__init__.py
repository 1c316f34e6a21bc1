"""Training-data pipeline operators. Nothing else in the library imports this
subpackage; each operator sits in a module of its own and works on plain
DataFrames, ``queries`` holds the registered queries and ``sql`` their twins."""

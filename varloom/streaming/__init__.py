"""No streaming operators: the reference work has none. The row operators of
``varloom.operators.rows`` that look at one row at a time also accept a streaming frame."""

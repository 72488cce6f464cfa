"""Table-level operators: DataFrame(s) in, lazy DataFrame out."""

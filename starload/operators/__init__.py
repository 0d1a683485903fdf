"""Set-based table operators, DataFrame in and DataFrame out."""

"""Plan building blocks shared by the operators: loops, skew handling, numbering."""

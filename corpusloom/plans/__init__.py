"""Jobs: compositions of operators over the tables of a corpus."""

"""Layer builds: which table is made from which."""

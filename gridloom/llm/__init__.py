"""Training-data operators (see each module); nothing else in the package imports this one."""

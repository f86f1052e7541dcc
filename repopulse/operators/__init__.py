"""DataFrame -> DataFrame operators. None of them starts a job or does I/O,
except where its docstring says so."""

"""Reading inputs and writing evidence."""

"""Loading tables into the data model and writing them back."""

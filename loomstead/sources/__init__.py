"""Tables, dumps and files."""

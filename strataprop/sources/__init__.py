"""Tables, delimited dimension files and saved artefacts."""

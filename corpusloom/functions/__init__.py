"""See the package README for the modules of this part."""

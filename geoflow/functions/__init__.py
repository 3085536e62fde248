"""SQL expression builders."""

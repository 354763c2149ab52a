"""Column functions; every one but the pluggable text encoder stays inside the JVM."""

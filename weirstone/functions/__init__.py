"""Column expressions shared by every builder; all stay inside the JVM."""

"""The geometry kernel: JTS operations as JVM functions on WKB."""

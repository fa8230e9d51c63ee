"""Row, load, reference and link steps: pure DataFrame functions plus thin table writers."""

"""What the operators return, as SQL, where SQL can express it."""

CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'),
                   (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), written AS (
  SELECT *, replace(replace(text, '\', '\0'), '</turn>', '\1') AS body,
         replace(replace(replace(role, '\', '\0'), '</turn>', '\1'), ':', '\2') AS head
  FROM turns
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                       FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(4 + length(head) + 2 + length(body) + 8)::BIGINT AS formatted_chars,
       count(*) FILTER (WHERE role = 'assistant') AS n_examples
FROM written GROUP BY conv_id
"""

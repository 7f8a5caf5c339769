SELECT * FROM o_messages

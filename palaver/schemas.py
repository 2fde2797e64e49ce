"""Schemas of the logical tables, the chat-export documents and the event catalogue."""

from __future__ import annotations

SERVERS = (
    "server_id long, server_name string, created_at timestamp_ntz, "
    "monitored_from timestamp_ntz, active boolean"
)
USERS = (
    "user_id long, discord_id long, current_username string, "
    "created_at timestamp_ntz, last_seen timestamp_ntz"
)
USERNAME_HISTORY = (
    "user_id long, username string, changed_from string, changed_at timestamp_ntz, change_no int"
)
MESSAGES = (
    "message_id long, server_id long, channel_id long, channel_name string, user_id long, "
    "content string, created_at timestamp_ntz, edited_at timestamp_ntz, "
    "deleted_at timestamp_ntz, is_deleted boolean, reply_to_message_id long, thread_id long"
)
REACTIONS = "id long, message_id long, emoji string, user_id long, added_at timestamp_ntz"
SERVER_MEMBERS = (
    "server_id long, user_id long, joined_at timestamp_ntz, left_at timestamp_ntz, "
    "is_active boolean"
)

TABLES = {
    "servers": SERVERS,
    "users": USERS,
    "username_history": USERNAME_HISTORY,
    "messages": MESSAGES,
    "reactions": REACTIONS,
    "server_members": SERVER_MEMBERS,
}

# One document per exported channel or thread. Ids are strings: the JSON reader renders a
# number into a string field, so both forms load.
EXPORT = (
    "guild struct<id:string,name:string>, "
    "channel struct<id:string,name:string,type:string>, "
    "messages array<struct<id:string,timestamp:string,timestampEdited:string,content:string,"
    "author:struct<id:string,name:string,nickname:string,discriminator:string>,"
    "attachments:array<struct<fileName:string>>,"
    "reference:struct<messageId:string>>>"
)

EVENT_CATALOGUE = (
    "title string, date string, category string, source_channel string, raw_text string"
)

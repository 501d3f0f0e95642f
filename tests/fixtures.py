"""Hand-made raw ledger rows; each one exercises a known trap (see FIXTURES.md)."""

TX_HEADER = (
    "hash,nonce,block_hash,block_number,transaction_index,from_address,to_address,value,gas,"
    "gas_price,input,block_timestamp,max_fee_per_gas,max_priority_fee_per_gas,transaction_type"
)

TX = [
    TX_HEADER,
    "0xt1,0,0xb1,100,0,0xa1,0xc1,84155363699941767867374641,21000,50000000000,0x,1438918233,,,0",
    "0xt2,0,0xb1,100,1,0xa2,0xc1,1,21000,50000000001,0x,1438918233,,,0",
    "0xt3,0,0xb2,101,0,0xa1,,0,90000,1,0x60,1441065600,,,0",
    "0xt4,0,0xb2,101,1,0xa1,0xc1,7,21000.9,1,0x,1441065599,,,0",
    "0xt5,0,0xb3,12x,0,0xa1,0xc1,5,21000,1,0x,1441065600,,,0",
    '0xt6,0,0xb3,102,0,0xa1,0xc1,5,21000,1,"0x,ff",1441065600,,,0',
    "0xt7,0,0xb3, 1_03 ,0,0xa1,0xs2,9,21000,1,0x,1441065600,,,0",
    "0xt8,0,0xb3,5.0,0,0xa1,0xc1,5,21000,1,0x,1441065600,,,0",
    "0xt9,0,0xb3,104,0,0xa1,0xc1,5,21000,1",
    "0xt10,0,0xb4,105,0,0xa1,0xs1,3,21000,1,0x,1441065600,,,0",
]
TX_KEPT = ["0xt1", "0xt2", "0xt3", "0xt4", "0xt7", "0xt10"]
# The same ledger without t4, whose gas '21000.9' is not integer text.
TX_NO_T4 = [r for r in TX if not r.startswith("0xt4,")]

CONTRACTS = [
    "address,bytecode,function_sighashes,is_erc20,is_erc721,block_number",
    "0xc1,0x60,0xab,True,False,90",
    "0xc1,0x60,0xab,False,False,91",
    "0xc2,0x60,0xab,true,False,91",
    '0xc3,0x60,"0xab,0xcd",False,False,92',
    "0xc4,0x60,,False,False,93",
]

REGISTRY = [
    '{"success":true,"result":{'
    '"one.example":{"id":1,"category":"Phishing","status":"Offline","addresses":["0xs1","0xs2"]},'
    '"two.example":{"id":2,"category":"Fake ICO","status":"Active","addresses":["0xs1"]},'
    '"three.example":{"id":3,"category":"","status":"Active","addresses":["0xs2"]},'
    '"four.example":{"id":4,"category":"Scamming","status":"Active","addresses":[]}}}'
]

BLOCK_HEADER = (
    "number,hash,parent_hash,nonce,sha3_uncles,logs_bloom,transactions_root,state_root,"
    "receipts_root,miner,difficulty,total_difficulty,size,extra_data,gas_limit,gas_used,"
    "timestamp,transaction_count,base_fee_per_gas"
)

H32 = "0x" + "ab" * 32
H256 = "0x" + "cd" * 256


def block(number, miner, size, sha3_uncles=H32, arity=19):
    fields = [
        str(number), H32, H32, "0x42", sha3_uncles, H256, H32, H32, H32, miner, "1", "1",
        str(size), "0x", "8000000", "21000", "1438918233", "1", "",
    ]
    return ",".join(fields[:arity])


# Twelve miners; m01 and m02 tie at 500 bytes for ninth place (address breaks the tie).
BLOCKS = [BLOCK_HEADER] + [
    block(1, "0xm01", 500), block(2, "0xm02", 500),
    block(3, "0xm03", 900), block(4, "0xm04", 800), block(5, "0xm05", 700),
    block(6, "0xm06", 650), block(7, "0xm07", 640), block(8, "0xm08", 630),
    block(9, "0xm09", 620), block(10, "0xm10", 610),
    block(11, "0xm11", 100), block(12, "0xm12", 50),
    block(13, "0xm12", 60),                              # m12 twice -> 110
    block(14, "0xm11", 9999, arity=18),                 # 18 fields: dropped
    block(15, "0xm11", 40, sha3_uncles=""),             # '' -> -1 byte
    block(16, "0xm11", 30, sha3_uncles="0x"),           # '0x' -> 0 byte
]
